"""The queries run over the supplied test tables, with the SQL they are checked by."""
