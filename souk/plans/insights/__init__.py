"""

The definitions are ours; every one is plain DataFrame code over the same
retail tables as the reports.
"""
