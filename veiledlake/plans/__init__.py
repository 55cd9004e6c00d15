"""The two hops as whole plans, and the jobs that run them."""
