"""DataFrame-to-DataFrame operators, free of any table's column names."""
