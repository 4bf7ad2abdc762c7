"""tidemark: trade and price analytics as Spark DataFrame transformations.

Every operator is a ``DataFrame -> DataFrame`` function that Catalyst plans;
per-symbol positional operators run on the blocked sequence plan in
``tidemark.plans.sequence`` so that no symbol is ever processed by one task.
"""

__version__ = "0.1.0"
