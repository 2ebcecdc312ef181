"""telarium.streaming"""
