"""Query plans over the driver tables: stand-in rules that turn the driver
tables into the shapes the operators take, the query catalog, and the
DuckDB SQL used as the correctness oracle."""
