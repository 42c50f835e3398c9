"""typolens: brand-typo analytics and data-quality operators as DataFrame transformations."""
