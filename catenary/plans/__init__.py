"""Named queries over the tables, each with the SQL that says the same where SQL can."""
