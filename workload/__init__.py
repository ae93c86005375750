"""Registered queries over the benchmark tables, each with the SQL it is compared with."""
