"""Column-level building blocks; none of them runs Python on executors."""
