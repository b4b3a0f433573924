"""DataFrame operators: profiles, vectors, similarity, resampling, models and metrics."""
