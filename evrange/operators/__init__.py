"""DataFrame operators; each takes and returns DataFrames and names its columns."""
