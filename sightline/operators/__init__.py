"""DataFrame-to-DataFrame operators, parameterised by column names."""
