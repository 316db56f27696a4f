"""linecorpus.operators"""
