"""waitlens: waiting-list supply and demand analytics as Spark DataFrame functions.

Layers
------
functions/  Column helpers with R-compatible null, rounding, date semantics.
operators/  Generic DataFrame operators (projection, predicates, joins,
            aggregation, reshape, ranking, set operations).
sources/    Declared schemas, readers and writers, the catalogue of domain tables.
plans/      Domain pipelines: referral enrichment, rejection rates, cube, gap...
registry    Parameters, shared facts and the named analyses.
workflow    Run the analyses on configured inputs and publish the results.
"""

__version__ = "0.1.0"
