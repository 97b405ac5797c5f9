"""wattloom: EV-charging event analytics as plain PySpark jobs."""
