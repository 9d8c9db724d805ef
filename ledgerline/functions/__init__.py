"""ledgerline."""
