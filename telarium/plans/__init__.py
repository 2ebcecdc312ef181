"""telarium.plans"""
