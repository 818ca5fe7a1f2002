"""Where results go: appended tables, replaced snapshots, merged tables, managed tables, logs."""
