"""windrow: context windows over ordered tokens or vectors, and training on them, as Spark jobs."""
