"""genoframe.operators"""
