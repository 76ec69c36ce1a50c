"""SQL statements that state each query's expected result independently of the DataFrame code."""
