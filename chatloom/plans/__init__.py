"""Ready-made plans: the tasks as SQL, the chat views over the test tables, and the query list."""
