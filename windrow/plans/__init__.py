"""Operators put together: the whole training job, the registered queries and their SQL."""
