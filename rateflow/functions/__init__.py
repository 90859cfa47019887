"""Column expressions; all of them native, none of them UDFs."""
