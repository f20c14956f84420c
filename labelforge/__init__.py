"""labelforge: catalogue records to a labelled dataset and a text classifier, on Spark.

Every public function takes and returns DataFrames or Columns.  Column names, rule
tables, phrases and word lists are arguments.
"""
