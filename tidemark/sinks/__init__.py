"""Writers: versioned tracker, landed files, snapshots."""
