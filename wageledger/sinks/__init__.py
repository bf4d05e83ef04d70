"""Writers: landed CSV snapshots, and tables in their three refresh styles."""
