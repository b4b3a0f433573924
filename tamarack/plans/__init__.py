"""End-to-end flows: ingest, features, splits, exploration and training."""
