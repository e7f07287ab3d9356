"""Registered queries: each module pairs whole-table Spark jobs with the SQL they must equal."""
