"""telarium.operators"""
