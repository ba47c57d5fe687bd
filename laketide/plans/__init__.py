"""The pipeline's stage plans: bronze ingest, silver conform, gold
dimensions / facts / rollup, the daily runner, and the stand-in mapping of
the driver's TPC-H-style tables onto the pipeline's tables."""
