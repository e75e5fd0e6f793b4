"""Pipeline operators: each is a DataFrame -> DataFrame function."""
