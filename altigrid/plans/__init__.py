"""Input views over the test tables, registered queries, their oracles, and jobs."""
