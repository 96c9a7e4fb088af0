"""orderlens: order analytics on Spark.

Stream decode -> validate -> fraud flag -> route, warehouse load with
insert-if-absent, staging / customer / revenue / fraud models and
data-quality checks, all as DataFrame -> DataFrame functions so Catalyst
plans the whole lineage.
"""

__version__ = "0.1.0"
