"""Training-data pipeline operators: one module per operator, plus the query
module that binds them to the test tables. Nothing else in the library
imports this subpackage."""
