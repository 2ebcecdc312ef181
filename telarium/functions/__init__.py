"""telarium.functions"""
