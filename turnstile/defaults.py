"""HR column names used by the reference pipeline.

These are defaults in one place; every operator takes column names as
parameters and never refers to these literals itself.
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's choices for identical results)
# ---------------------------------------------------------------------------

# Column types of the HR table (explicit, so the CSV reader needs no
# inference pass over the data); epoch-second columns are bigint.
HR_SCHEMA = (
    "Employee_ID int, Position string, Department string, Age int, Gender string, "
    "is_active string, Education int, Education_Field string, "
    "Environment_Satisfaction int, Job_Satisfaction int, Marital_Status string, "
    "Standard_Hours int, Hourly_Rate int, Monthly_Rate int, Monthly_Income int, "
    "Salary_Scale string, Num_Companies_Worked int, Percent_Salary_Hike int, "
    "Performance_Rating int, Performance_Scale string, Total_Working_Years int, "
    "Work_Life_Balance int, Start_Date bigint, Years_At_Company bigint"
)

# The configured columns: mandatory, then optional.
HR_COLUMNS = (
    "Employee_ID", "Position", "is_active", "Education", "Job_Satisfaction",
    "Monthly_Income", "Salary_Scale", "Performance_Scale", "Percent_Salary_Hike",
    "Performance_Rating", "Total_Working_Years", "Start_Date", "Department", "Age",
    "Gender", "Education_Field", "Marital_Status", "Standard_Hours", "Hourly_Rate",
    "Monthly_Rate", "Work_Life_Balance", "Years_At_Company",
)

# Columns the sentinel rule leaves untouched.
HR_EXEMPT = ("Employee_ID", "Education", "Job_Satisfaction", "Marital_Status")

# Columns holding epoch seconds that become yyyy-MM-dd strings.
HR_DATES = ("Years_At_Company", "Start_Date")

# Legacy variant: only Start_Date is a date column.
HR_DATES_LEGACY = ("Start_Date",)

# Legacy variant: the fixed drop list.
HR_LEGACY_DROP = ("Years_At_Company", "Salary_Scale", "Performance_Scale", "Standard_Hours")

# String values the sentinel rule turns into missing (whole value, case-sensitive).
SENTINEL_STRINGS = ("null", "0")

# Output date format (Python '%Y-%m-%d').
DATE_FORMAT = "yyyy-MM-dd"

# Threshold for dropping mostly-missing columns (strict >).
MISSING_THRESHOLD = 50.0

# Identifier, label, group/value pair for the mode fill.
HR_ID = "Employee_ID"
HR_LABEL = "is_active"
HR_GROUP = "Department"
HR_GROUP_VALUE = "Position"

# Feature blocks of the network input, in order.
HR_CATEGORICAL = ("Position", "Department", "Gender", "Education_Field")
HR_NUMERIC = (
    "Age", "Education", "Job_Satisfaction", "Hourly_Rate", "Monthly_Rate",
    "Monthly_Income", "Percent_Salary_Hike", "Performance_Rating",
    "Total_Working_Years", "Work_Life_Balance", "Start_Date",
)

# Random forest settings (last max_features wins: 'sqrt').
FOREST_PARAMS = dict(numTrees=1000, maxDepth=4, minInstancesPerNode=2,
                     featureSubsetStrategy="sqrt", seed=0)

# Network: three hidden layers of 6 units, 2 outputs; 120 epochs, batch 32.
MLP_HIDDEN = (6, 6, 6)
MLP_MAX_ITER = 120
MLP_BLOCK_SIZE = 32

# Split and balancing seeds / sizes.
TEST_SIZE = 0.2
SPLIT_SEED = 0
SMOTE_SEED = 42
SMOTE_K = 1

# Imputer defaults (chained equations): rounds, tolerance.
IMPUTE_MAX_ITER = 10
IMPUTE_TOL = 1e-3
