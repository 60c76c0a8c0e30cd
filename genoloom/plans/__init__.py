"""Named queries over the test tables, each paired with independent SQL where SQL can say it."""
