"""textmart: text and market analytics as Spark DataFrame jobs.

Sub-packages:
  functions  - column expressions (tokenising, rules, scores)
  operators  - DataFrame -> DataFrame jobs (frequencies, TF-IDF, collocations, OLAP, trends, ...)
  sources    - readers and writers (JSON arrays, word lists, CSV, stored web pages)
  plans      - end-to-end analyses composed from operators
  streaming  - incremental versions of the term-monitoring counts
"""

__version__ = "0.1.0"
