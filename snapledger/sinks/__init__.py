"""Writers for snapshots, layer tables and published files."""
