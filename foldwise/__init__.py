"""Tabular feature engineering as Spark DataFrame plans.

The public functions live in four groups:

* ``foldwise.sources``   - readers, writers and the stores used between runs
* ``foldwise.functions`` - column expressions without state
* ``foldwise.operators`` - operators that fit statistics or reshape a frame
* ``foldwise.plans``     - whole workflows: profiling, training, selection
"""

__version__ = "0.1.0"
