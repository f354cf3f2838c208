"""Plans that put operators together: validation, reports and whole migrations."""
