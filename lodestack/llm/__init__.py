"""Operators for training-data pipelines. Nothing else in lodestack imports this subpackage."""
