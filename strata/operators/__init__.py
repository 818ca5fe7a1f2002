"""DataFrame → DataFrame operators; each takes static and streaming input alike unless it says otherwise."""
