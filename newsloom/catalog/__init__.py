"""The registered queries, each with the same question as plain SQL where SQL can ask it."""
