"""wayfold.functions"""
