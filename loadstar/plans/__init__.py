"""loadstar.plans"""
