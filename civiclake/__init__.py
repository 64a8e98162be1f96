"""civiclake: a PySpark lakehouse for place-and-year keyed public data.

Layers: ``sources`` (scans of landed payloads), ``functions`` (Column -> Column
expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (gold builders, marts, pipeline), ``sinks`` (table writes) and
``streaming`` (incremental bronze ingestion of landed files).
"""

from civiclake.session import get_spark, scratch_dir  # noqa: F401

KEY = "cod_mun_ibge_7"
YEAR = "ano"
