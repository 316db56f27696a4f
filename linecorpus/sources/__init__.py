"""linecorpus.sources"""
