"""linecorpus.functions"""
