"""Training-data operators: dedup, filters, decontamination, packing, output.

Nothing else in the library imports this subpackage.
"""
