"""Writers: tables, upserts, snapshots and archives."""
