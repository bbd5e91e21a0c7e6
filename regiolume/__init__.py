"""Regional indicators as lazy Spark plans.

``functions``  Column expressions (text, dates, numbers, recodes)
``sources``    readers for awkward published layouts, and sinks
``operators``  DataFrame -> DataFrame steps shared by the jobs
``plans``      whole indicator jobs, one public function each
``catalog``    every operator and job bound to the benchmark tables, with the SQL that checks it
"""
