"""genoframe.plans"""
