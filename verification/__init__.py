"""One query per operator over the test tables, each with its SQL counterpart."""
