"""Bronze scans, driver-table fixtures and file-system metadata calls."""
