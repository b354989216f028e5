"""Recommenders and the pipeline that runs them."""
