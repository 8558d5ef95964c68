"""sparkrec — rating prediction and recommender evaluation on Spark DataFrames.

Sub-packages:

* ``sources``   – schemas, file readers/writers, and the test-data fixtures.
* ``functions`` – column expressions shared by the operators.
* ``operators`` – the recommenders, features, evaluation and tuning.
* ``plans``     – the registered queries, their SQL twins and the hybrid pipeline.
* ``streaming`` – intentionally empty (the reference has no streaming work).
"""

__version__ = "0.1.0"
