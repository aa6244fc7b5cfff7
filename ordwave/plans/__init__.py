"""Plans over landed tables: reports, reconciliation, audits; the registry."""
