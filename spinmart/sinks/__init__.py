"""Writers: mart append, replaced exports, staged extracts."""
