"""faultline: telemetry fault analytics as Spark DataFrame operators.

Every operator takes a DataFrame (plus parameters) and returns a DataFrame.
Plans are lazy except for what must be known to build them: thresholds, cut
points, key skew, model fits and pinned segments run jobs when called.
Sub-packages:

* ``sources``   - table readers, fixture views, writers (A1-A8)
* ``functions`` - column-expression helpers shared by all operators
* ``operators`` - cleaning, labelling, series, events, splits, linear
                  algebra, models and evaluation (B-J)
* ``plans``     - the segmented (range-partitioned) scan used for ordered
                  operators, the exact distributed quantile, and the
                  registered query catalogue with its DuckDB oracle
* ``streaming`` - Structured Streaming forms of labelling and tickets (K)
"""

__version__ = "0.1.0"
