"""genoframe.sources"""
