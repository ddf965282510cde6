"""An HR-shaped CSV made here: the table's columns, a byte-order mark, CRLF
line ends, blank cells and zeros where real files have them."""

import re

from turnstile.defaults import HR_SCHEMA

COLUMNS = re.findall(r"(\w+) \w+(?:,|$)", HR_SCHEMA)
N = 12


def _row(i: int) -> dict:
    return {
        "Employee_ID": 5001 + i, "Position": "" if i == 4 else ("Clerk", "Engineer", "Lead")[i % 3],
        "Department": ("Sales", "Lab")[i % 2], "Age": 25 + 3 * i, "Gender": ("Female", "Male")[i // 2 % 2],
        "is_active": "No" if i % 4 == 1 else "Yes", "Education": "" if i in (2, 9) else 1 + i % 4,
        "Education_Field": ("Medical", "Other", "Life Sciences")[i % 3], "Environment_Satisfaction": 1 + i % 4,
        "Job_Satisfaction": 1 + (i + 1) % 4, "Marital_Status": ("Single", "Married")[i % 2],
        "Standard_Hours": 40 if i == 0 else 0, "Hourly_Rate": 30 + 5 * i,
        "Monthly_Rate": "" if i in (1, 3, 5, 7) else 9000 + 700 * i,
        "Monthly_Income": "" if i in (6, 10) else 2000 + 450 * i, "Salary_Scale": "", "Performance_Scale": "",
        "Num_Companies_Worked": i % 5, "Percent_Salary_Hike": 11 + i % 7, "Performance_Rating": 3 + i % 2,
        "Total_Working_Years": 1 + i, "Work_Life_Balance": 1 + i % 3, "Start_Date": 1418804688 + 86400 * 30 * i,
        "Years_At_Company": "" if i in (0, 8) else 1300000000 + 86400 * 50 * i,
    }


def write(path: str) -> str:
    rows = [COLUMNS] + [[str(_row(i)[c]) for c in COLUMNS] for i in range(N)]
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        f.write("".join(",".join(r) + "\r\n" for r in rows))
    return path
