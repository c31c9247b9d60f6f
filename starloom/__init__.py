"""starloom: dimensional-warehouse building blocks on the Spark DataFrame API.

Calendar dimensions, dense surrogate keys, versioned (SCD 1/2/3/hybrid)
dimensions, point-in-time fact resolution with an unknown member, bounded
window reloads, snapshot facts and star-schema analytics. Every operator is a
lazy DataFrame transformation; nothing row-sized is pulled to the driver.
"""

from starloom.schemas import END_OF_TIME, UNKNOWN_KEY, Scd2Spec

__all__ = ["END_OF_TIME", "UNKNOWN_KEY", "Scd2Spec"]
