"""linecorpus.plans"""
