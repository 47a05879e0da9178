"""wayfold.plans"""
