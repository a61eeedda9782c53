"""ledgerloom: data conversion and reshaping jobs as Spark DataFrame functions.

functions/  column expressions, code tables, hot-group-safe ranking
operators/  the jobs (flatten, prune, qualify, lookup, incremental, loads, exclude, checks)
plans/      run directories, the whole conversion run, the registered queries
sources/    parquet sources, declared schemas, test-data role frames
streaming/  foreachBatch adapters for the incremental jobs
"""
