"""tidemark: change-data-capture analytics on Spark.

Layers:
  * Bronze  - decoded, append-only change events (one row per message).
  * Silver  - latest state per business key, ordered by event time, deletes applied.
  * Gold    - marts rebuilt from Silver.
Every operator is a DataFrame -> DataFrame function; streaming wrappers live in
``tidemark.streaming``.
"""

from tidemark.entities import ENTITIES, EntitySpec, entity

__all__ = ["ENTITIES", "EntitySpec", "entity"]
__version__ = "0.1.0"
