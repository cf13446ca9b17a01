"""Sources and sinks: JDBC (S1, S2, A1), CSV and local rows (S5, S6), lake
batches and text (S3, S4, K1-K3, K6, K7, U3)."""
