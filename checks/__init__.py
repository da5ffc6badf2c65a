"""What the driver runs: named queries over the test tables and the SQL they must equal."""
