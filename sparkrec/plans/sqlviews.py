"""The fixture views in DuckDB SQL, for the oracle twins of the queries.

``with_views(body, ...)`` prefixes a query body with exactly the CTEs it
needs (dependencies resolved). The rating fixture the halves are cut from is
a parameter; the names inside the body stay ``half_a``/``half_b``/
``candidates``.
"""

from __future__ import annotations

# Dialect pieces (FIXTURES.md §3).
J = "cast(json_extract_string(props,'$.k') as int)"


def H(u: str = "user_id", i: str = "item_id", seed: int = 0) -> str:
    return (f"cast('0x'||substr(md5(concat(cast({u} as varchar),':',cast({i} as varchar),':{seed}')),1,4) as int)")


RATINGS_SQL = {
    "ratings_supp": """select user_id,item_id,stars from (select o_custkey user_id,l_suppkey item_id,
 cast(ceil(l_quantity/10) as int) stars,
 row_number() over (partition by o_custkey,l_suppkey order by l_shipdate desc,l_quantity desc) rn
 from lineitem join orders on o_orderkey=l_orderkey) x where rn=1""",
    "ratings_bt": """select user_id,item_id,stars from (select o_custkey user_id,concat(p_brand,'/',p_type) item_id,
 cast(ceil(l_quantity/10) as int) stars,
 row_number() over (partition by o_custkey,concat(p_brand,'/',p_type) order by l_shipdate desc,l_quantity desc) rn
 from lineitem join orders on o_orderkey=l_orderkey join part on p_partkey=l_partkey) x where rn=1""",
    "ratings_ev": f"""select user_id,item_id,stars from (select user_id,{J} item_id,
 case event_type when 'purchase' then 5 when 'signup' then 4 when 'click' then 3 when 'view' then 2 else 1 end stars,
 row_number() over (partition by user_id,{J} order by ts desc,event_id desc) rn from events) x where rn=1""",
}

STRING_ITEMS = {"ratings_bt"}


def _candidates_sql(ratings: str) -> str:
    if ratings in STRING_ITEMS:
        sel = "cast('0x'||substr(md5(item_id),1,4) as int)%10=0"
        cold = "concat(item_id,'~cold')"
    else:
        sel = "item_id%10=0"
        cold = "item_id+1000000000"
    return f"""select row_number() over (order by user_id,item_id)-1 row_no,user_id,item_id,stars from (
 select user_id,item_id,stars from half_b
 union all select user_id+1000000000,item_id,stars from half_b where user_id%40=0
 union all select user_id,{cold},stars from half_b where {sel}
 union all select user_id+1000000000,{cold},stars from half_b where user_id%40=0 and {sel}) x"""


USER_PROFILE_SQL = f"""select c_custkey user_id,coalesce(r.average_stars,2.5) average_stars,coalesce(r.review_count,0) review_count,
 coalesce(e.useful,0) useful,coalesce(e.funny,0) funny,coalesce(e.cool,0) cool,coalesce(e.fans,0) fans,
 coalesce(e.c0,0) compliment_hot,coalesce(e.c1,0) compliment_more,coalesce(e.c2,0) compliment_profile,coalesce(e.c3,0) compliment_cute,coalesce(e.c4,0) compliment_list,coalesce(e.c5,0) compliment_note,
 coalesce(e.c6,0) compliment_plain,coalesce(e.c7,0) compliment_cool,coalesce(e.c8,0) compliment_funny,coalesce(e.c9,0) compliment_writer,coalesce(e.c10,0) compliment_photos
 from customer left join (select user_id,avg(stars) average_stars,count(*) review_count from half_a group by user_id) r on r.user_id=c_custkey
 left join (select user_id,sum(case when event_type='view' then 1 else 0 end) useful,sum(case when event_type='click' then 1 else 0 end) funny,
 sum(case when event_type='purchase' then 1 else 0 end) cool,sum(case when event_type='signup' then 1 else 0 end) fans,
 {','.join(f"sum(case when {J}%11={n} then 1 else 0 end) c{n}" for n in range(11))}
 from events group by user_id) e on e.user_id=c_custkey"""


def _flag(key: str, ko: int, to: int) -> str:
    return (f"case when (s_suppkey+{ko})%4=0 then '' else concat(',\"{key}\":',case when (s_suppkey+{ko})%5=0 then 'null' "
            f"when (s_suppkey+{to})%3=0 then '\"True\"' else '\"False\"' end) end")


ITEM_PROFILE_SQL = ("""select s_suppkey item_id,coalesce(r.stars,2.5) stars,coalesce(r.review_count,0) review_count,
 case when s_suppkey%7=3 then null else concat('{"WiFi":"free"',"""
                    + ",".join([_flag("BusinessAcceptsCreditCards", 0, 0), _flag("GoodForKids", 1, 2),
                                _flag("RestaurantsReservations", 2, 4), _flag("RestaurantsGoodForGroups", 3, 6),
                                """case when (s_suppkey+4)%4=0 then '' else concat(',"Alcohol":',case when s_suppkey%13=0 then 'null' when s_suppkey%3=0 then '"none"' else '"full_bar"' end) end""",
                                _flag("RestaurantsTakeOut", 5, 10), _flag("OutdoorSeating", 6, 12),
                                _flag("HasTV", 7, 14)])
                    + """,'}') end attributes
 from supplier left join (select item_id,round(avg(stars)*2)/2 stars,count(*) review_count from half_a group by item_id) r
 on r.item_id=s_suppkey""")


def view_defs(ratings: str = "ratings_supp", seed: int = 0) -> dict[str, tuple[str, list[str]]]:
    """name -> (sql, dependencies)."""
    d = {name: (sql, []) for name, sql in RATINGS_SQL.items()}
    d["ratings"] = (f"select user_id,item_id,stars from {ratings}", [ratings])
    d["half_a"] = (f"select user_id,item_id,stars from ratings where {H(seed=seed)}%2=0", ["ratings"])
    d["half_b"] = (f"select user_id,item_id,stars from ratings where {H(seed=seed)}%2=1", ["ratings"])
    d["candidates"] = (_candidates_sql(ratings), ["half_b"])
    d["user_profile"] = (USER_PROFILE_SQL, ["half_a"])
    d["item_profile"] = (ITEM_PROFILE_SQL, ["half_a"])
    return d


def with_views(body: str, *names: str, ratings: str = "ratings_supp",
               extra: list[tuple[str, str]] | None = None, seed: int = 0) -> str:
    """``WITH <needed fixture views>, <extra ctes in order> <body>``."""
    defs = view_defs(ratings, seed)
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for dep in defs[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    # materialised: the models chain CTEs that several others read, which inlining would multiply
    ctes = [f"{n} as materialized ({defs[n][0]})" for n in order]
    ctes += [f"{n} as materialized ({sql})" for n, sql in (extra or [])]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body
