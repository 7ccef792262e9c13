"""Writers for CSV, JSON, archives, result tables, models and message streams."""
