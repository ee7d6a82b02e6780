"""Composed jobs (warehouse build, training, sampling, serving) and the query registry."""
