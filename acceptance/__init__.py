"""The library's operators bound to the test tables, and the SQL they must agree with."""
