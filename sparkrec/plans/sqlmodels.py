"""SQL (DuckDB) twins of the model operators, as lists of named CTEs.

Each generator takes the names of its input views and a prefix, and returns
``[(cte_name, sql), ...]`` whose last element is the output. They compose:
the stacking features chain several models in one statement.
"""

from __future__ import annotations


def clamp_sql(x: str, lo, hi) -> str:
    if lo is None and hi is None:
        return x
    return f"case when {x}>{float(hi)} then {float(hi)} when {x}<{float(lo)} then {float(lo)} else {x} end"


def item_cf(train: str, pairs: str, pre: str = "cf", k: int = 20, min_co: int = 35, p: float = 2.5,
            lo=1.0, hi=5.0) -> list[tuple[str, str]]:
    """Output view ``{pre}_pred(user_id,item_id,prediction,route)``."""
    c = []
    c.append((f"{pre}_ist", f"select item_id,avg(stars) item_mean,count(*) item_count from {train} group by item_id"))
    c.append((f"{pre}_ust", f"select user_id,avg(stars) user_mean from {train} group by user_id"))
    c.append((f"{pre}_cp", f"select distinct user_id,item_id from {pairs}"))
    c.append((f"{pre}_expand", f"""select k.user_id,k.item_id,t.item_id other,cast(t.stars as double) r_other
 from {pre}_cp k join {train} t on t.user_id=k.user_id
 where k.user_id in (select user_id from {pre}_ust) and k.item_id in (select item_id from {pre}_ist)"""))
    c.append((f"{pre}_needed", f"select distinct least(item_id,other) x,greatest(item_id,other) y from {pre}_expand"))
    c.append((f"{pre}_tot", f"select item_id,count(*)::hugeint n,sum(stars)::hugeint s from {train} group by item_id"))
    c.append((f"{pre}_su", f"""select n.x,n.y,count(*)::hugeint n,sum(a.stars)::hugeint a,sum(b.stars)::hugeint b,sum(a.stars*b.stars)::hugeint ab,
 sum(a.stars*a.stars)::hugeint aa,sum(b.stars*b.stars)::hugeint bb
 from {pre}_needed n join {train} a on a.item_id=n.x join {train} b on b.item_id=n.y and b.user_id=a.user_id
 group by n.x,n.y"""))
    c.append((f"{pre}_ex", f"""select s.x,s.y,cast(s.n as bigint) n_co,cast(i.n as double) nx,cast(j.n as double) ny,
 cast(i.n*j.n*s.ab-i.n*j.s*s.a-j.n*i.s*s.b+s.n*i.s*j.s as double) iab,cast(i.n*i.n*s.aa-2*i.n*i.s*s.a+s.n*i.s*i.s as double) iaa,
 cast(j.n*j.n*s.bb-2*j.n*j.s*s.b+s.n*j.s*j.s as double) ibb
 from {pre}_su s join {pre}_tot i on i.item_id=s.x join {pre}_tot j on j.item_id=s.y"""))
    c.append((f"{pre}_st", f"select x,y,n_co,iab/(nx*ny) sab,iaa/(nx*nx) saa,ibb/(ny*ny) sbb from {pre}_ex"))
    c.append((f"{pre}_w0", f"""select x,y,n_co,case when n_co>={min_co} and saa>0 and sbb>0 then sab/(sqrt(saa)*sqrt(sbb))
 else 0.0 end w0 from {pre}_st"""))
    c.append((f"{pre}_wa", f"select x,y,n_co,w0,w0*pow(abs(w0),{float(p) - 1.0}) weight from {pre}_w0"))
    c.append((f"{pre}_wb", f"""select x item_id,y other,n_co,weight from {pre}_wa
 union all select y,x,n_co,weight from {pre}_wa where x<>y"""))
    c.append((f"{pre}_nb", f"""select e.user_id,e.item_id,e.other,e.r_other,w.weight,
 row_number() over (partition by e.user_id,e.item_id order by round(w.weight,12) desc,e.other) rank
 from {pre}_expand e join {pre}_wb w on w.item_id=e.item_id and w.other=e.other where w.weight>0"""))
    c.append((f"{pre}_top", f"""select user_id,item_id,sum(r_other*weight)/sum(weight) nb_pred,count(*) n_neighbors
 from {pre}_nb where rank<={k} group by user_id,item_id"""))
    p0 = ("case when i.item_mean is null then coalesce(u.user_mean,2.5) when u.user_mean is null then i.item_mean "
          "when t.nb_pred is not null then t.nb_pred else u.user_mean end")
    route = ("case when i.item_mean is null and u.user_mean is null then 'both_cold' when i.item_mean is null then 'cold_item' "
             "when u.user_mean is null then 'cold_user' when t.nb_pred is not null then 'neighbors' else 'no_neighbor' end")
    c.append((f"{pre}_pred", f"""select cp.user_id,cp.item_id,{clamp_sql(p0, lo, hi)} prediction,{route} route
 from {pre}_cp cp left join {pre}_ust u on u.user_id=cp.user_id left join {pre}_ist i on i.item_id=cp.item_id
 left join {pre}_top t on t.user_id=cp.user_id and t.item_id=cp.item_id"""))
    return c


HIST = [("count_0_1", 0, 1), ("count_1_2", 1, 2), ("count_2_3", 2, 3), ("count_3_4", 3, 4),
        ("count_4_5", 4, 5), ("count_5_plus", 5, None)]
REPORT_COLS = ["count", "rmse", "avg_diff", "avg_pos_diff", "pos_count", "avg_neg_diff", "neg_count"] + [h[0] for h in HIST]


def report_select(diff: str, src: str) -> str:
    """One-row report over ``diff`` from ``src``."""
    hist = []
    for name, lo, hi in HIST:
        cond = f"abs({diff})>={lo}" + (f" and abs({diff})<{hi}" if hi is not None else "")
        hist.append(f"cast(coalesce(sum(case when {cond} then 1 else 0 end),0) as bigint) {name}")
    return f"""select cast(count(*) as bigint) count,round(sqrt(avg(({diff})*({diff}))),6) rmse,round(avg({diff}),6) avg_diff,
 round(coalesce(avg(case when {diff}>0 then {diff} end),-999.0),6) avg_pos_diff,
 cast(coalesce(sum(case when {diff}>0 then 1 else 0 end),0) as bigint) pos_count,
 round(coalesce(avg(case when {diff}<0 then {diff} end),-999.0),6) avg_neg_diff,
 cast(coalesce(sum(case when {diff}<0 then 1 else 0 end),0) as bigint) neg_count,
 {','.join(hist)} from {src}"""


def user_knn(train: str, pairs: str, pre: str = "kn", k: int = 15, lo=1.0, hi=5.0) -> list[tuple[str, str]]:
    """Output ``{pre}_pred(user_id,item_id,prediction,n_neighbors)``."""
    c = [(f"{pre}_g", f"select avg(stars) mu from {train}"),
         (f"{pre}_cp", f"select distinct user_id,item_id from {pairs}"),
         (f"{pre}_expand", f"""select c.user_id,c.item_id,t.user_id v,cast(t.stars as double) r_v from {pre}_cp c
 join {train} t on t.item_id=c.item_id where c.user_id in (select user_id from {train})"""),
         (f"{pre}_needed", f"select distinct least(user_id,v) x,greatest(user_id,v) y from {pre}_expand"),
         (f"{pre}_sim", f"""select n.x,n.y,count(*) n_common,1.0/(sum((a.stars-b.stars)*(a.stars-b.stars))/count(*)+1.0) sim
 from {pre}_needed n join {train} a on a.user_id=n.x join {train} b on b.user_id=n.y and b.item_id=a.item_id group by n.x,n.y"""),
         (f"{pre}_simb", f"select x user_id,y v,sim from {pre}_sim union all select y,x,sim from {pre}_sim where x<>y"),
         (f"{pre}_nb", f"""select e.user_id,e.item_id,e.v,e.r_v,s.sim,
 row_number() over (partition by e.user_id,e.item_id order by round(s.sim,12) desc,e.v) rank
 from {pre}_expand e join {pre}_simb s on s.user_id=e.user_id and s.v=e.v where s.sim>0"""),
         (f"{pre}_top", f"""select user_id,item_id,sum(sim*r_v)/sum(sim) nb_pred,count(*) n_neighbors from {pre}_nb
 where rank<={k} group by user_id,item_id"""),
         (f"{pre}_pred", f"""select cp.user_id,cp.item_id,{clamp_sql('coalesce(t.nb_pred,g.mu)', lo, hi)} prediction,
 coalesce(t.n_neighbors,0) n_neighbors from {pre}_cp cp cross join {pre}_g g
 left join {pre}_top t on t.user_id=cp.user_id and t.item_id=cp.item_id""")]
    return c


def slope_one(train: str, pairs: str, pre: str = "so", lo=1.0, hi=5.0) -> list[tuple[str, str]]:
    """Outputs ``{pre}_dev(x,y,n_co,dev)`` and ``{pre}_pred(user_id,item_id,prediction)``."""
    return [
        (f"{pre}_g", f"select avg(stars) mu from {train}"),
        (f"{pre}_um", f"select user_id,avg(stars) user_mean from {train} group by user_id"),
        (f"{pre}_cp", f"select distinct user_id,item_id from {pairs}"),
        (f"{pre}_known", f"""select * from {pre}_cp where user_id in (select user_id from {train})
 and item_id in (select item_id from {train})"""),
        (f"{pre}_expand", f"""select k.user_id,k.item_id,t.item_id other from {pre}_known k
 join {train} t on t.user_id=k.user_id"""),
        (f"{pre}_needed", f"select distinct least(item_id,other) x,greatest(item_id,other) y from {pre}_expand"),
        (f"{pre}_dev", f"""select n.x,n.y,count(*) n_co,avg(cast(a.stars as double)-b.stars) dev from {pre}_needed n
 join {train} a on a.item_id=n.x join {train} b on b.item_id=n.y and b.user_id=a.user_id group by n.x,n.y"""),
        (f"{pre}_devb", f"select x item_id,y other,dev from {pre}_dev union all select y,x,-dev from {pre}_dev where x<>y"),
        (f"{pre}_agg", f"""select e.user_id,e.item_id,avg(d.dev) mean_dev from {pre}_expand e
 join {pre}_devb d on d.item_id=e.item_id and d.other=e.other group by e.user_id,e.item_id"""),
        (f"{pre}_pred", f"""select cp.user_id,cp.item_id,{clamp_sql(
            'case when k.user_id is null then g.mu else u.user_mean+coalesce(a.mean_dev,0.0) end', lo, hi)} prediction
 from {pre}_cp cp cross join {pre}_g g left join {pre}_um u on u.user_id=cp.user_id
 left join {pre}_known k on k.user_id=cp.user_id and k.item_id=cp.item_id
 left join {pre}_agg a on a.user_id=cp.user_id and a.item_id=cp.item_id"""),
    ]


def _hash_mod(col: str, n: int, seed: int = 0) -> str:
    return f"cast(cast('0x'||substr(md5(concat(cast({col} as varchar),':{seed}')),1,4) as int)%{n} as int)"


def co_cluster(train: str, pairs: str, pre: str = "cc", ku: int = 5, ki: int = 5, epochs: int = 2,
               seed: int = 0, lo=1.0, hi=5.0) -> list[tuple[str, str]]:
    """Fixed-epoch co-clustering. Output ``{pre}_pred(user_id,item_id,prediction,cu,ci)``."""
    c = [(f"{pre}_r", f"select user_id,item_id,cast(stars as double) stars from {train}"),
         (f"{pre}_g", f"select avg(stars) mu from {pre}_r"),
         (f"{pre}_um", f"select user_id,avg(stars) user_mean from {pre}_r group by user_id"),
         (f"{pre}_im", f"select item_id,avg(stars) item_mean from {pre}_r group by item_id"),
         (f"{pre}_rm", f"""select r.user_id,r.item_id,r.stars,u.user_mean,i.item_mean from {pre}_r r
 join {pre}_um u on u.user_id=r.user_id join {pre}_im i on i.item_id=r.item_id"""),
         (f"{pre}_gu", f"select cast(range as int) c from range({ku})"),
         (f"{pre}_gi", f"select cast(range as int) c from range({ki})"),
         (f"{pre}_cu0", f"select user_id,{_hash_mod('user_id', ku, seed)} cu from {pre}_um"),
         (f"{pre}_ci0", f"select item_id,{_hash_mod('item_id', ki, seed)} ci from {pre}_im")]

    def avgs(e: int, cu: str, ci: str):
        rr = f"{pre}_rr{e}"
        return [
            (rr, f"select r.*,u.cu,i.ci from {pre}_r r join {cu} u on u.user_id=r.user_id join {ci} i on i.item_id=r.item_id"),
            (f"{pre}_au{e}", f"""select g.c cu,coalesce(a.m,(select mu from {pre}_g)) au from {pre}_gu g
 left join (select cu,avg(stars) m from {rr} group by cu) a on a.cu=g.c"""),
            (f"{pre}_ai{e}", f"""select g.c ci,coalesce(a.m,(select mu from {pre}_g)) ai from {pre}_gi g
 left join (select ci,avg(stars) m from {rr} group by ci) a on a.ci=g.c"""),
            (f"{pre}_aco{e}", f"""select gu.c cu,gi.c ci,coalesce(a.m,(select mu from {pre}_g)) aco from {pre}_gu gu cross join {pre}_gi gi
 left join (select cu,ci,avg(stars) m from {rr} group by cu,ci) a on a.cu=gu.c and a.ci=gi.c"""),
        ]

    for e in range(epochs):
        cu, ci = f"{pre}_cu{e}", f"{pre}_ci{e}"
        c += avgs(e, cu, ci)
        est = "(x.stars-(a.aco+x.user_mean-u.au+x.item_mean-i.ai))"
        c.append((f"{pre}_ue{e}", f"""select x.user_id,g.c,sum({est}*{est}) err from (select m.*,ci.ci from {pre}_rm m
 join {ci} ci on ci.item_id=m.item_id) x cross join {pre}_gu g join {pre}_aco{e} a on a.cu=g.c and a.ci=x.ci
 join {pre}_au{e} u on u.cu=g.c join {pre}_ai{e} i on i.ci=x.ci group by x.user_id,g.c"""))
        c.append((f"{pre}_cu{e + 1}", f"""select user_id,c cu from (select user_id,c,row_number() over
 (partition by user_id order by round(err,9),c) rn from {pre}_ue{e}) z where rn=1"""))
        c.append((f"{pre}_ie{e}", f"""select x.item_id,g.c,sum({est}*{est}) err from (select m.*,cu.cu from {pre}_rm m
 join {pre}_cu{e + 1} cu on cu.user_id=m.user_id) x cross join {pre}_gi g join {pre}_aco{e} a on a.cu=x.cu and a.ci=g.c
 join {pre}_au{e} u on u.cu=x.cu join {pre}_ai{e} i on i.ci=g.c group by x.item_id,g.c"""))
        c.append((f"{pre}_ci{e + 1}", f"""select item_id,c ci from (select item_id,c,row_number() over
 (partition by item_id order by round(err,9),c) rn from {pre}_ie{e}) z where rn=1"""))
    cu, ci = f"{pre}_cu{epochs}", f"{pre}_ci{epochs}"
    c += avgs(epochs, cu, ci)
    e = epochs
    p0 = ("case when u.user_mean is not null and i.item_mean is not null then a.aco+(u.user_mean-au.au)+(i.item_mean-ai.ai) "
          "when u.user_mean is not null then u.user_mean when i.item_mean is not null then i.item_mean else g.mu end")
    c.append((f"{pre}_pred", f"""select cp.user_id,cp.item_id,{clamp_sql(p0, lo, hi)} prediction,xu.cu,xi.ci
 from (select distinct user_id,item_id from {pairs}) cp cross join {pre}_g g
 left join {pre}_um u on u.user_id=cp.user_id left join {pre}_im i on i.item_id=cp.item_id
 left join {cu} xu on xu.user_id=cp.user_id left join {ci} xi on xi.item_id=cp.item_id
 left join {pre}_au{e} au on au.cu=xu.cu left join {pre}_ai{e} ai on ai.ci=xi.ci
 left join {pre}_aco{e} a on a.cu=xu.cu and a.ci=xi.ci"""))
    return c
