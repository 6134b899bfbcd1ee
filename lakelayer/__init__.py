"""lakelayer: layered (bronze / silver / gold) retail tables on Spark.

Every operator is a DataFrame-in, DataFrame-out function built from
``pyspark.sql.functions``; actions happen only in the sinks
(``lakelayer.sources.tables``) and in the layer plans (``lakelayer.plans``).
"""

from lakelayer.functions.exprs import QUARANTINE_REASONS
from lakelayer.operators.quality import QualityRules, run_quality_gate

__all__ = ["QUARANTINE_REASONS", "QualityRules", "run_quality_gate"]
