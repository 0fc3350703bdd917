"""millrace: DataFrame operators for building, loading and understanding data flows."""
