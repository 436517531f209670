"""tessera: a Spark-native retail analytics mart.

Layers (mirroring a classic warehouse build):

* ``sources``   - source tables (read from parquet through an adapter) and
                  the literal reference dimensions.
* ``plans.gen`` - synthesis pipelines that derive new tables from the sales
                  facts (acquisition channel, payment method, fulfilment,
                  marketing spend, surveys, return events).
* ``plans.dims`` / ``plans.facts`` - the dimension and fact views.
* ``plans.checks`` / ``plans.measures`` - integrity checks, distribution
                  reports and business measures.

Everything is DataFrame code: no Python UDFs, no custom Catalyst rules.
"""

from tessera.config import MartConfig, get_session
from tessera.mart import Mart

__all__ = ["MartConfig", "Mart", "get_session"]
