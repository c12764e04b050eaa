"""The tournament tables and the plans that build them."""
