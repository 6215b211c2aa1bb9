"""ledgersieve: turns messy transaction feeds into trusted tables, as Spark jobs."""
