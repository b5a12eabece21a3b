"""The registered queries, each with the SQL that checks it where SQL can say it."""
