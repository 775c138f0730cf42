"""Writers for reports and models."""
