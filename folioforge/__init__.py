"""Layout, text repair, parsing and typed extraction of long-form documents on Spark."""
