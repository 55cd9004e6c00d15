"""DataFrame operators: each takes DataFrames and returns one, without running a job."""
