"""lakefold: a Spark-native availability lake.

Public entry points (all take and return Spark DataFrames):

* ``lakefold.functions.hashing``: ``add_metadata``, ``with_content_hash``
* ``lakefold.operators.shape``: ``flatten_availability``, ``flatten_hotels``,
  ``flatten_hotel_availability``, ``enforce_schema``, ``hotel_url``
* ``lakefold.operators.merge``: ``merge_changes``, ``merge_state``, ``dedup_latest``
* ``lakefold.operators.fold``: ``latest_per_key``, ``change_events``, ``fold_state``,
  ``valid_intervals``, ``asof_last``
* ``lakefold.operators.select``: ``search``, ``number_pages``, ``cut_page_chain``, ...
* ``lakefold.operators.validate``: ``validate``, ``split_valid``, ``check_programs``
* ``lakefold.sources``: JSON pages / routes / trips / calendars, HTML links and scripts
* ``lakefold.storage.table.ArchiveTable``: save (append / overwrite / merge),
  current, compact, expire, info
* ``lakefold.plans.jobs``: ``run_flight_pipeline``, ``run_hotel_pipeline``
* ``lakefold.streaming.ingest``: ``ingest_stream``, ``dedup_stream``
* ``lakefold.plans.sqlrun``: ``run_sql``, ``run_sql_report``
"""

__version__ = "0.1.0"
