"""rankfold — Spark-native operators for click-through-rate feature tables,
ranking metrics, score blending and in-impression ranking.

Every operator is a lazy ``DataFrame -> DataFrame`` or ``Column -> Column``
function.  Nothing is collected to the driver except a documented handful of
bounded scalars (one row of min/max per scaler, one count per partition).
"""

__version__ = "0.1.0"
