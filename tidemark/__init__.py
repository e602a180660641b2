"""tidemark: ingest published statistical files and analyse them, on Spark.

Every public function takes and returns DataFrames; nothing is collected and no
Python runs on the executors.
"""
