"""Regional economic benchmarks as Spark DataFrame operators.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing here starts a session, and nothing collects data rows.
"""
