"""Readers: delimited files, whole objects, storage inventories and catalog listings."""
