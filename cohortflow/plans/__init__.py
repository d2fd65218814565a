"""The profile plans (M1-M5) and the end-to-end batch job."""
