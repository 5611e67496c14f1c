"""Fixed values that results depend on, written out apart from the library."""

# City names looked for in an address, with the city and state they stand for, in the order that decides.
PLACES = (
    ("mumbai", "Mumbai", "Maharashtra"),
    ("delhi", "Delhi", "Delhi"),
    ("new delhi", "New Delhi", "Delhi"),
    ("kolkata", "Kolkata", "West Bengal"),
    ("bangalore", "Bangalore", "Karnataka"),
    ("bengaluru", "Bangalore", "Karnataka"),
    ("chennai", "Chennai", "Tamil Nadu"),
    ("hyderabad", "Hyderabad", "Telangana"),
    ("pune", "Pune", "Maharashtra"),
    ("ahmedabad", "Ahmedabad", "Gujarat"),
    ("jaipur", "Jaipur", "Rajasthan"),
    ("lucknow", "Lucknow", "Uttar Pradesh"),
    ("patna", "Patna", "Bihar"),
    ("bhubaneswar", "Bhubaneswar", "Odisha"),
    ("ranchi", "Ranchi", "Jharkhand"),
    ("guwahati", "Guwahati", "Assam"),
    ("chandigarh", "Chandigarh", "Chandigarh"),
    ("kochi", "Kochi", "Kerala"),
    ("thiruvananthapuram", "Thiruvananthapuram", "Kerala"),
    ("surat", "Surat", "Gujarat"),
    ("nagpur", "Nagpur", "Maharashtra"),
    ("indore", "Indore", "Madhya Pradesh"),
    ("bhopal", "Bhopal", "Madhya Pradesh"),
    ("coimbatore", "Coimbatore", "Tamil Nadu"),
    ("visakhapatnam", "Visakhapatnam", "Andhra Pradesh"),
    ("vijayawada", "Vijayawada", "Andhra Pradesh"),
    ("kanpur", "Kanpur", "Uttar Pradesh"),
    ("varanasi", "Varanasi", "Uttar Pradesh"),
    ("noida", "Noida", "Uttar Pradesh"),
    ("gurgaon", "Gurgaon", "Haryana"),
    ("gurugram", "Gurgaon", "Haryana"),
)

# Words looked for in a column name.
KEYWORDS = (
    "email", "phone", "address", "name", "dob", "birth", "date", "account_number", "account_no",
    "account_num", "bank_account", "account", "medical", "record", "location", "blood", "gender", "balance",
    "salary", "diagnosis", "doctor", "campaign", "customer", "student", "patient", "employee", "member", "id",
    "key", "amount", "income", "credit", "debit", "transaction",
)

# The profile features, in vector order.
PROFILE_FEATURES = (
    "email_match_ratio", "phone_match_ratio", "date_match_ratio", "credit_card_match_ratio",
    "bank_account_match_ratio", "medical_record_match_ratio", "numeric_ratio", "alphabetic_ratio",
    "alphanumeric_ratio", "unique_ratio", "avg_length", "min_length", "max_length", "null_or_empty",
    "sample_count", "std_length", "avg_word_count", "digit_value_ratio",
)

# The sensitivity of each kind of personal data.
SENSITIVITY_POLICY = {
    "NON_PII": "LOW",
    "DIRECT_IDENTIFIER": "HIGH",
    "EMAIL": "HIGH",
    "PHONE": "HIGH",
    "ADDRESS": "HIGH",
    "DATE_OF_BIRTH": "HIGH",
    "BANK_ACCOUNT_NUMBER": "HIGH",
    "FINANCIAL_INFORMATION": "HIGH",
    "HEALTH_INFORMATION": "HIGH",
    "MEDICAL_RECORD_NUMBER": "HIGH",
    "PERSON_NAME": "MEDIUM",
    "DEMOGRAPHIC_INFORMATION": "MEDIUM",
    "LOCATION": "MEDIUM",
}
