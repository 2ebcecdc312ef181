"""telarium.sources"""
