"""Layered batch analytics on PySpark: landing -> bronze -> silver -> star schema."""
