"""linecorpus.streaming"""
