"""Composite jobs: extract (I1), promote (I2), transform/load (I3, I4),
run capture (I5), ML jobs (I6-I8) and the text job (I9)."""
