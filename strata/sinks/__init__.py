"""Writers (slice replace, upsert, overwrite, clustering, JDBC), table contracts, quality log."""
