"""playerlake: a Spark-native medallion pipeline for online-game analytics.

Layers: ``streaming`` (raw files -> bronze), ``plans.silver`` (typed, decoded,
deduplicated), ``plans.gold`` (denormalised facts and report tables) and
``plans.analysis`` (the business questions). ``plans.medallion.run`` executes
all layers against real raw files; ``plans.queries`` exposes every operator as a
query over the driver test tables.
"""

__version__ = "0.1.0"
