"""Plan-level building blocks: ordered scans that survive hot keys, and the
exact distributed quantile.  The registered query catalogue lives in
``faultline.plans.catalog`` (imported lazily by ``__spark_entry__``)."""
