"""The composite models and the jobs that materialise them."""
