"""Change-data work on lakehouse tables, written as ordinary PySpark.

Layers, lowest first:

* ``functions``  - column expressions (partition transforms, comparisons, stock rules);
* ``operators``  - DataFrame in, DataFrame out (merge, diff, dedup, layout writes);
* ``sources``    - delimited files, JDBC, derived sample data;
* ``plans``      - tables with versions, pipeline state, and the pipelines over them;
* ``acceptance`` - every operator as a query over the test tables, with its SQL twin.
"""
