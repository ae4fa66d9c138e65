"""DataFrame -> DataFrame operators, grouped by task."""
