"""DataFrame operators: DataFrames in, DataFrames out, lazy unless the docstring says otherwise."""
