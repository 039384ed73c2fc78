"""Order-book replay, sampling, delta coding and task ledgers as Spark plans."""
