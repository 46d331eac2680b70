"""Play-by-play sports event analytics as PySpark DataFrame operators.

``sources`` reads nested game documents, ``operators`` turns DataFrames into
DataFrames, ``sinks`` writes tables idempotently, ``plans`` strings them into
the user-level dataflows, ``streaming`` drives the same plan from new files.
"""

__version__ = "0.1.0"
