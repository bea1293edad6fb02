"""grainline: table profiling, audited joins, coverage expansion, group ranking,
conditional pivots and the plan-landscape pipeline, written as Spark DataFrame code.

Subpackages:
  sources    table loading, schema contracts, test stand-ins, sinks
  functions  column-level cleaning helpers (pure ``Column -> Column``)
  operators  reusable ``DataFrame -> DataFrame`` operators
  plans      parameterised multi-step pipelines (the landscape build)
"""

__version__ = "0.1.0"
