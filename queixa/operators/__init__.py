"""Cleaning, modelling, aggregation and window operators."""
