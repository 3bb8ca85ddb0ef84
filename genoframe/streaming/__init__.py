"""genoframe.streaming"""
